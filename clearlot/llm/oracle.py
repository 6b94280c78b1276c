"""DuckDB SQL for the corpus queries that SQL can state; the others are tested against plain versions."""

ORACLE: dict[str, str] = {}


def _centroids(dimensions: int = 64, clusters: int = 8, rounds: int = 10, seed: int = 3) -> str:
    """Chained steps: ``m0`` are the first centroids, ``a<n>`` the assignment of a round, ``m<n+1>`` its means."""
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""m0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), vec_id) - 1 AS k, v FROM kept
            QUALIFY k < {clusters})""",
    ]
    for number in range(rounds + 1):
        steps.append(f"""a{number} AS MATERIALIZED (
            SELECT vec_id, kept.v AS v, k, m.v AS middle, CAST(list_sum(list_transform(range(1, {dimensions + 1}),
                lambda i: (kept.v[i] - m.v[i]) * (kept.v[i] - m.v[i]))) AS BIGINT) AS far
            FROM kept, m{number} AS m
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far, k) = 1)""")
        if number < rounds:
            steps.append(f"""m{number + 1} AS MATERIALIZED (
                SELECT k, coalesce(found.v, m.v) AS v FROM m{number} AS m LEFT JOIN (
                    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
                        SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM a{number}, range(1, {dimensions + 1}) AS r(i)
                        GROUP BY k, i) GROUP BY k) AS found USING (k))""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(k AS INTEGER) AS cluster, far AS distance,
            CAST(sum(far) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(list_transform(middle, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
        FROM a{rounds}"""


ORACLE["op12_centroids"] = _centroids()

#: Windows are compared as lists of words; ``gone`` numbers the words that a window covers which stands earlier.
ORACLE["op11_substring_dedup"] = r"""
WITH split AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS MATERIALIZED (
    SELECT doc_id, place, array_to_string(words[place:place + 19], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS place FROM split WHERE len(words) >= 20)),
again AS (
    SELECT doc_id, place FROM windows QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, place) > 1),
gone AS (SELECT doc_id, list(DISTINCT place + step) AS places FROM again, range(20) AS r(step) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(array_to_string(list_filter(words, lambda word, nth: NOT list_contains(coalesce(places, []), nth)), ' '), ''))
        AS kept_sha256
FROM split LEFT JOIN gone USING (doc_id)
"""

_TERMS = r"""unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

#: Every term of an item meets every document that holds it; scores are in whole numbers, as the query has them.
ORACLE["op13_ranked_search"] = f"""
WITH counted AS MATERIALIZED (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TERMS} FROM documents) GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
norms AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM lengths, total),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, total GROUP BY term, docs),
asked AS (SELECT item_id, {_TERMS} FROM benchmark),
found AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM found WHERE score > 0 QUALIFY rank <= 20
"""
