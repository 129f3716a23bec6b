"""SQL for another engine that gives the rows of registered queries, where SQL can."""

# Sources in order share all words by weight, each up to three times its size; a
# source stops there if it would get more from what those of a lower ratio leave.
_MIXING = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS hash
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM s),
c AS (
    SELECT *, (sum(source_size) OVER ())::BIGINT AS everything, (sum(weight) OVER ())::BIGINT AS weights,
        coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS lower_sizes, coalesce(sum(weight) OVER before, 0)::BIGINT AS lower_weights
    FROM r
    WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, 3 * source_size * (weights - lower_weights) < weight * (everything - lower_sizes) AS stops FROM c),
l AS (
    SELECT *, coalesce(sum(3 * source_size) FILTER (stops) OVER (), 0)::BIGINT AS stopped_sizes,
        coalesce(sum(weight) FILTER (stops) OVER (), 0)::BIGINT AS stopped_weights
    FROM o),
t AS (
    SELECT source, source_size, CASE WHEN stops THEN (3 * source_size)::DOUBLE
        ELSE (weight * (everything - stopped_sizes))::DOUBLE / (weights - stopped_weights)::DOUBLE END AS target
    FROM l),
b AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats,
        target - (CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END * source_size)::DOUBLE AS budget
    FROM t),
u AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY hash ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM d)
SELECT u.doc_id, u.size, b.source_size, b.target, u.size * (b.repeats
    + CASE WHEN budget > 0 AND (upto <= budget OR (upto - size <= budget AND upto - budget < budget - (upto - size))) THEN 1 ELSE 0 END) AS taken
FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source
"""

_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

# All pairs of equal words of a text, islands of pairs at one distance, and of islands at one place the shortest period.
_RUNS = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_reduce(
            list_concat([4294967295::BIGINT], list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
            lambda c, b: list_reduce(
                list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)))) AS state
    FROM documents),
h AS (SELECT *, xor(state, 4294967295) AS h, xor(state, 4294967295) // 10 AS g, len(w)::BIGINT AS n FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS MATERIALIZED (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w
    FROM p),
u AS MATERIALIZED (SELECT r, unnest(range(n)) AS i, unnest(w) AS word FROM t),
-- A word that is not there four times in the text is in no run.
f AS (SELECT * FROM u QUALIFY count(*) OVER (PARTITION BY r, word) >= 4),
m AS (SELECT x.r, x.i, y.i - x.i AS q FROM f x JOIN f y ON x.r = y.r AND x.word = y.word AND y.i > x.i),
s AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m),
e AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
o AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM e GROUP BY r, start, length),
c AS (SELECT DISTINCT o.r, unnest(range(o.start + o.period, o.start + o.length)) AS i FROM o),
k AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT u.* FROM u ANTI JOIN c USING (r, i)) GROUP BY r),
l AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM o GROUP BY r),
b AS (
    SELECT * FROM o
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1)
SELECT t.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.period::BIGINT AS period,
    (1000 * b.length // b.period)::BIGINT AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM t LEFT JOIN l USING (r) LEFT JOIN b USING (r) LEFT JOIN k USING (r)
"""

# Every distance in every round; a round's three tables follow from those of the round before.
_START = """
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
o AS (SELECT e, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, e) - 1 AS n FROM v),
c0 AS MATERIALIZED (SELECT n, e FROM o WHERE n < 16)"""
_ASSIGN = """,
d{0} AS (
    SELECT v.r, c.n, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::BIGINT AS distance
    FROM v CROSS JOIN c{0} c),
a{0} AS MATERIALIZED (
    SELECT r, n, distance FROM d{0} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, n) = 1)"""
_MOVE = """,
s{0} AS (
    SELECT a.n, u.i, sum(v.e[u.i])::HUGEINT AS total, count(*)::HUGEINT AS size
    FROM a{0} a JOIN v USING (r) CROSS JOIN (SELECT unnest(range(1, 65)) AS i) u
    GROUP BY a.n, u.i),
m{0} AS (SELECT n, list(((total - ((total % size) + size) % size) // size)::BIGINT ORDER BY i) AS e FROM s{0} GROUP BY n),
c{1} AS MATERIALIZED (SELECT c.n, coalesce(m.e, c.e) AS e FROM c{0} c LEFT JOIN m{0} m USING (n))"""
_CENTROIDS = (
    _START
    + "".join(_ASSIGN.format(i) + _MOVE.format(i, i + 1) for i in range(3))
    + _ASSIGN.format(3)
    + """
SELECT v.vec_id, a.n::INTEGER AS cluster, a.distance,
    (sum(a.distance) OVER (PARTITION BY a.n))::BIGINT AS cluster_inertia, (sum(a.distance) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a3 a JOIN v USING (r) JOIN c3 c ON a.n = c.n
"""
)

ORACLE = {"op5_mixing": _MIXING, "op9_top_k": _TOP_K, "op11_periodic_runs": _RUNS, "op12_centroids": _CENTROIDS}
