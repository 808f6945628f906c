"""DuckDB SQL for the registered queries that SQL can express over whole tables."""

from __future__ import annotations

_COMPONENTS = """
reach(id, seen) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT l.a, r.seen FROM reach r JOIN links l ON l.b = r.id
)
"""

OP1 = f"""
WITH RECURSIVE v AS (
    SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings
), nodes AS (SELECT id FROM v),
links AS MATERIALIZED (
    SELECT x.id AS a, y.id AS b
    FROM v x JOIN v y ON x.label = y.label AND x.id <> y.id
    WHERE list_dot_product(x.e, x.e) > 0 AND list_dot_product(y.e, y.e) > 0
      AND list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)) >= 0.93
), {_COMPONENTS}
SELECT v.id AS vec_id, (SELECT count(*) FROM links l WHERE l.a = v.id) AS n_links,
       m.component_id, v.id = m.component_id AS kept
FROM v JOIN (SELECT id, min(seen) AS component_id FROM reach GROUP BY id) m ON m.id = v.id
"""

OP3 = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id AS id, list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+'), lambda x: x <> '') AS ws
    FROM documents
), s AS (
    SELECT id, CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
    FROM w
), nodes AS (SELECT id FROM s),
e AS MATERIALIZED (SELECT id, len(sh) AS n, hash(unnest(sh)) AS h FROM s),
links AS MATERIALIZED (
    SELECT x.id AS a, y.id AS b
    FROM e x JOIN e y ON x.h = y.h AND x.id <> y.id
    GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), {_COMPONENTS}
SELECT s.id AS doc_id, len(s.sh)::BIGINT AS n_shingles, m.component_id, s.id = m.component_id AS kept
FROM s JOIN (SELECT id, min(seen) AS component_id FROM reach GROUP BY id) m ON m.id = s.id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _op2() -> str:
    from .queries import URL_RULES

    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
    parts = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return f"""
WITH p AS (
    SELECT row_number() OVER () AS i, page_id,
           translate(regexp_extract(coalesce(url, ''), {parts}, 1), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(coalesce(url, ''), {parts}, 2) AS path
    FROM pages
), r(rhost, rpath, v) AS (VALUES {rules}),
fit AS (
    SELECT i, host, arg_max(rhost || rpath, len(rhost || rpath)) AS rule, arg_max(v, len(rhost || rpath)) AS v
    FROM p JOIN r ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath)
    GROUP BY i, host
), bad AS (
    SELECT host FROM fit WHERE host <> '' GROUP BY host HAVING sum(CASE v WHEN 'block' THEN 1 ELSE -1 END) > 0
)
SELECT page_id, p.host, path, rule,
       CASE WHEN fit.i IS NOT NULL THEN v WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN fit ON fit.i = p.i LEFT JOIN bad ON bad.host = p.host
"""


def _op4() -> str:
    """The checksum byte by byte from its table, then the network with its rounds written out."""
    from .sharding import ROUNDS, _FACTOR, _FACTOR2, _PRIME, round_key

    steps = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    table = "n"
    for _ in range(8):
        table = f"(SELECT {steps} FROM (SELECT {table} AS c))"
    rounds = []
    for i in range(ROUNDS):
        x = "r" if i % 2 == 0 else "l"
        first = f"(({x} + {round_key(1, i)}) % {_PRIME} * {_FACTOR} % {_PRIME})"
        mixed = f"(xor({first}, {first} >> 13) * {_FACTOR2} % {_PRIME})"
        new = f"(l + {mixed}) % a AS l, r" if i % 2 == 0 else f"l, (r + {mixed}) % b AS r"
        rounds.append(f"f{i + 1} AS (SELECT k, a, b, n, step, {new} FROM f{i})")
    return f"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, {table} AS c FROM range(256) q(n))),
d AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS MATERIALIZED (
    SELECT doc_id, size::BIGINT AS size, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
        lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) AS text_crc32
    FROM d, tab
), z AS (
    SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS k, count(*) OVER () AS n FROM c
), g AS (
    SELECT *, CASE WHEN (floor(sqrt(n - 1)) + 1) >= 1 THEN (floor(sqrt(n - 1)) + 1)::BIGINT END AS a FROM z
), walk(k, a, b, n, x, step) AS (
    SELECT k, a, (n + a - 1) // a, n, k, 0 FROM g
    UNION ALL
    SELECT k, a, b, n, l * b + r, step FROM (
        WITH f0 AS (SELECT k, a, b, n, step + 1 AS step, x // b AS l, x % b AS r FROM walk WHERE step = 0 OR x >= n),
        {", ".join(rounds)}
        SELECT * FROM f{ROUNDS}
    )
), p AS (SELECT k, x FROM walk WHERE step > 0 AND x < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % 8)::INTEGER AS shard, x // 8 AS slot, NULL::INTEGER AS grown_shard, x AS position
FROM g JOIN p ON p.k = g.k
"""


def _op9() -> str:
    from .licenses import BASE_PHRASES, RARE_WORDS, TEMPLATES

    def strings(items):
        return "[" + ", ".join(f"'{x}'" for x in items) + "]"

    templates = ", ".join(f"({k}, '{label}', {strings(text.split())}, {strings(phrases)})"
                          for k, (label, text, phrases) in enumerate(TEMPLATES))
    bases = ", ".join(f"('{label}', {strings(phrase.split())})" for phrase, label in BASE_PHRASES)
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS i, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws
    FROM documents
), t(t, label, tw, phrases) AS (VALUES {templates}),
b(label, bw) AS (VALUES {bases}),
vocabulary AS (SELECT DISTINCT unnest(tw) AS w FROM t),
occ AS MATERIALIZED (
    SELECT i, pos, w FROM (SELECT i, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM d)
    WHERE w IN (FROM vocabulary)
), df AS (SELECT v.w, count(DISTINCT occ.i) AS df FROM vocabulary v LEFT JOIN occ ON occ.w = v.w GROUP BY v.w),
place AS (SELECT t, w, min(p) AS p FROM (SELECT t, unnest(tw) AS w, generate_subscripts(tw, 1) - 1 AS p FROM t) GROUP BY t, w),
rare AS (
    SELECT t, w, p, df, count(*) OVER (PARTITION BY t) AS n FROM (
        SELECT t, place.w, p, df, row_number() OVER (PARTITION BY t ORDER BY df, place.w) AS k
        FROM place JOIN df ON df.w = place.w) WHERE k <= {RARE_WORDS}
), cand AS (
    SELECT DISTINCT occ.i, rare.t, occ.pos - rare.p AS s FROM occ JOIN rare ON rare.w = occ.w
), agreed AS (
    SELECT c.i, c.t, c.s FROM cand c JOIN rare ON rare.t = c.t JOIN occ ON occ.i = c.i AND occ.pos = c.s + rare.p AND occ.w = rare.w
    GROUP BY c.i, c.t, c.s, rare.n HAVING count(*) >= greatest(2, ceil(0.6 * rare.n))
), found AS (
    SELECT a.i, t.label, len(list_filter(range(len(tw)), lambda k: a.s + k >= 0 AND ws[a.s + k + 1] IS NOT DISTINCT FROM tw[k + 1]))::DOUBLE
           / len(tw)::DOUBLE AS share
    FROM agreed a JOIN t ON t.t = a.t JOIN d ON d.i = a.i
    WHERE len(list_filter(phrases, lambda f: contains(
        ' ' || array_to_string(ws[greatest(a.s, 0) + 1 : greatest(a.s, 0) + len(tw) + least(a.s, 0)], ' ') || ' ', ' ' || f || ' '))) = len(phrases)
), base AS (
    SELECT d.i, b.label, unnest(list_filter(range(len(ws) - len(bw) + 1), lambda k: ws[k + 1 : k + len(bw)] = bw)) AS pos
    FROM d, b WHERE list_has_all(ws, bw)
), bs AS (SELECT i, count(*) AS n, min(pos) AS lo, max(pos) AS hi, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM base GROUP BY i),
ls AS (
    SELECT i, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
    FROM (SELECT i, label FROM base UNION ALL SELECT i, label FROM found) GROUP BY i
), sc AS (SELECT i, max(share) AS share FROM found GROUP BY i)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(bs.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(bs.labels, '') AS base_labels, coalesce(ls.labels, '') AS labels,
       CASE WHEN bs.i IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN bs ON bs.i = d.i LEFT JOIN ls ON ls.i = d.i LEFT JOIN sc ON sc.i = d.i
"""


def _op11(k: int = 16, rounds: int = 3) -> str:
    ctes = [f"""
v AS MATERIALIZED (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e
    FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {k})
)"""]
    for r in range(rounds + 1):
        ctes.append(f"""
a{r} AS MATERIALIZED (
    SELECT v.i, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, min((d, k)) AS best
    FROM (SELECT v.*, c.k, list_sum(list_transform(range(1, 65), lambda j: (v.e[j] - c.e[j]) * (v.e[j] - c.e[j])))::BIGINT AS d
          FROM v, c{r} c) v GROUP BY v.i
)""")
        if r < rounds:
            ctes.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c.k, coalesce(n.e, c.e) AS e FROM c{r} c LEFT JOIN (
        SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS e
        FROM (SELECT best[2] AS k, j, sum(e[j]) AS s, count(*) AS n FROM a{r}, range(1, 65) t(j) GROUP BY 1, 2) GROUP BY k
    ) n ON n.k = c.k
)""")
    last = f"a{rounds}"
    return "WITH " + ",".join(ctes) + f"""
SELECT a.vec_id, a.best[2]::INTEGER AS cluster, a.best[1]::BIGINT AS distance,
       (sum(a.best[1]) OVER (PARTITION BY a.best[2]))::BIGINT AS cluster_inertia, (sum(a.best[1]) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM {last} a JOIN c{rounds} c ON c.k = a.best[2]
"""


OP13 = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D ]+'), lambda x: x <> '') AS ws
    FROM documents
), f AS (
    SELECT doc_id, part,
           (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
           + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t))::INT
           + 8 * regexp_matches(t, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
    FROM d
), l AS (
    SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE l.toxic) AS n_toxic
    FROM f LEFT JOIN l ON l.doc_id = f.doc_id GROUP BY part, mask
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
    SELECT m.*, filter_order, step, (mask >> (ascii(substr(filter_order, step, 1)) - 65)) & 1 = 1 AS fails,
           coalesce(list_min(list_filter(range(1, 6), lambda k: (mask >> (ascii(substr(filter_order, k::INT, 1)) - 65)) & 1 = 1)), 6) AS gone
    FROM m, o, (SELECT unnest(range(1, 6))::INT AS step)
), r AS (
    SELECT part, filter_order, step, coalesce(sum(n) FILTER (WHERE gone > step), 0) AS kept,
           coalesce(sum(n) FILTER (WHERE gone = step), 0) AS removed,
           coalesce(sum(n) FILTER (WHERE fails AND gone < step), 0) AS redundant,
           coalesce(sum(n) FILTER (WHERE fails AND bit_count(mask) = 1), 0) AS unique_fails,
           coalesce(sum(n_good) FILTER (WHERE gone = step), 0) AS good_lost,
           coalesce(sum(n_toxic) FILTER (WHERE gone = step), 0) AS toxic_lost
    FROM s GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley
FROM r
"""

SQL = {
    "op1_embedding_dedup": OP1, "op2_url_filter": _op2(), "op3_minhash_dedup": OP3, "op4_sharding": _op4(),
    "op9_license_scan": _op9(), "op11_centroid_clusters": _op11(), "op13_filter_audit": OP13,
}
